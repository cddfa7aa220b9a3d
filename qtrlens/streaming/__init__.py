"""qtrlens.streaming"""
