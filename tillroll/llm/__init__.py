"""Operators that prepare text for training: quality, licences, chats, pages, toxicity, mixing,
near duplicates, shards and benchmark leaks.  Nothing else in the package imports this folder."""
