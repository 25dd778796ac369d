"""Query catalogue (Spark side and SQL twins) and end-to-end flows."""
