"""Sinks: topics, topic directories, quarantine, console."""
