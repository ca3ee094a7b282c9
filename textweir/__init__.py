"""textweir: a Spark-native engine for building, searching and analysing text corpora."""
