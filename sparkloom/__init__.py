"""sparkloom: a Spark-native document lakehouse (typed tables, text units, manifests, exact vector search)."""

__version__ = "0.1.0"
