"""quillstone: a Spark-native engine for regulatory question-and-answer corpora."""
