"""Stand-in input: documents, pages, control tables and deliveries that Spark
derives from the given tables, in the schemas that the operators read."""
