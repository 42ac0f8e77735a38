"""Relational operators: joins, dedupe/top-n, ids, responses, upserts, audits."""
