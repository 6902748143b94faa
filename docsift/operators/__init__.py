"""docsift.operators"""
