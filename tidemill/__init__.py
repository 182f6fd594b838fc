"""tidemill: batch, streaming and model jobs written as plain PySpark."""
