"""The queries by name, with SQL where SQL can express them."""

from __future__ import annotations

from larkspan.llm import queries as q

QUERIES = {name: f for name, f in vars(q).items() if name.startswith("op") and callable(f)}
ORACLES = {"op1_line_dedup": q.OP1_SQL, "op2_exact_dedup": q.OP2_SQL, "op4_warc": q.OP4_SQL, "op7_ngram_jaccard_join": q.OP7_SQL}
