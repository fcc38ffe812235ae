"""Document and design-asset analytics expressed as Spark DataFrame jobs."""
