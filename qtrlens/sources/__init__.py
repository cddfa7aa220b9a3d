"""qtrlens.sources"""
