"""Runnable jobs over plain folders; each has a command line, a settings file and a function that takes a session."""
