"""quillgraph: documents to knowledge graphs with Spark DataFrames."""

__version__ = "0.1.0"
