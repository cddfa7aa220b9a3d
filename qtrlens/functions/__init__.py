"""qtrlens.functions"""
