"""Web-shop event analytics as Spark DataFrame operators."""
