"""incidentmart: a Spark-native incident star-schema warehouse and its reports."""

__version__ = "0.1.0"
