"""docprep: turn extracted documents into reviewed question-answer training data on Spark."""
