"""donorlake: campaign-finance landing, conforming, master-table, quality and
delta-sync jobs expressed as Spark DataFrame / SQL / Structured Streaming."""

__version__ = "0.1.0"
