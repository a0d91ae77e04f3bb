"""rideloom - mobility analytics as Spark DataFrame operators."""
