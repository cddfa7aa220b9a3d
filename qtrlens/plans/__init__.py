"""qtrlens.plans"""
