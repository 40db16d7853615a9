"""threadmill: conversation analytics and training-data preparation as Spark plans."""
