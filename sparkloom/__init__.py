"""sparkloom: a PySpark-native engine for building, auditing and evaluating instruction corpora."""
