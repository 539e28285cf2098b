"""tagpulse: question-and-answer stream analytics as Spark jobs."""
