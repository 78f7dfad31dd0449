"""delayworks: operational-delay analytics as composable Spark DataFrame jobs."""
