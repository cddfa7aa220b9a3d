"""Operators for preparing large training corpora (dedup, sharding, WARC,
tokenising, packing, chat formatting, URL and quality filters).

Nothing else in the library imports this subpackage.
"""
