"""fundlake: a Spark-native engine for fund-document analytics."""
