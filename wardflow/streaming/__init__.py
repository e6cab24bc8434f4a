"""Event streams.  Every transform also runs on a batch frame, which is how replays work."""
