"""The row-local part of the pipeline over a stream."""
