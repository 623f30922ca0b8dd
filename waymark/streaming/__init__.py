"""Answers as they arrive: the replay's checks on a stream."""
