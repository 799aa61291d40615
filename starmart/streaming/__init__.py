"""Streaming: the change-feed form of the SCD2 apply."""
