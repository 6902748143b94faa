"""docsift.streaming"""
