"""walrill: change-data-capture streams as Spark dataflow."""
