"""Analytics over registers of annual company filings, and corpus preparation, on Spark."""
