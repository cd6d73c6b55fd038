"""tallywatch: transaction-risk analytics as Spark DataFrame and Structured Streaming plans."""
