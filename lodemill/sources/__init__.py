"""Readers and writers: corpus tables, blobs, streams, keyed stores."""
