"""Answer-time analytics for Q&A posts, as plain DataFrame functions on Spark."""
