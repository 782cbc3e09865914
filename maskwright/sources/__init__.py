"""Readers and writers: images, record shards, file trees, schema text, palettes."""
