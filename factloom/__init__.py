"""factloom: versioned, quality-checked analytical data on Spark."""
