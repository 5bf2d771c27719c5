"""tideline: change-data-capture, snapshot and corpus processing as Spark plans."""
