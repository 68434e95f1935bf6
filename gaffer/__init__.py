"""gaffer: snapshot-to-decision analytics as Spark DataFrame operators."""
