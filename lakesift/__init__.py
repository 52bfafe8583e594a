"""lakesift: table-quality and layered-lakehouse operators on the Spark DataFrame API."""

__version__ = "0.1.0"
