"""Writers of shards, token files, embedding files, nearest-word files and models.

All of them refuse a path that exists, and write as many files as the data needs.
"""
