"""Business-date driven lake processing written as Spark DataFrame plans."""
