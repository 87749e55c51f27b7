"""Panel analytics and corpus operators as plain DataFrame-to-DataFrame functions on Spark."""
