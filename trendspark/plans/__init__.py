"""Composite jobs (C1-C15): what a user calls. Each is a DataFrame function,
used as is for batch runs and inside ``foreachBatch`` / a streaming
aggregate for the streaming runs (see ``trendspark.streaming``)."""
