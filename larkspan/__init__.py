"""larkspan: a Spark-first engine for preparing large media and text corpora."""
