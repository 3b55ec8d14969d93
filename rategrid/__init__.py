"""Pay tables out of semi-structured documents, as Spark DataFrame operators."""
