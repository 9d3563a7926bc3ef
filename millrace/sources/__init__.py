"""Sources: topics, log files, change records, JDBC tables."""
