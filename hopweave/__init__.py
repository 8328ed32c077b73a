"""hopweave: multi-hop question-answering datasets over property graphs, as Spark DataFrame operators."""

__version__ = "0.1.0"
