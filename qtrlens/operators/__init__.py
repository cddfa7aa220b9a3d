"""qtrlens.operators"""
