"""Readers and writers: codecs, queues, the schema registry and the event store."""
