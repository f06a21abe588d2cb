"""lexloom: a Spark-native engine for citation graphs and large document collections."""
