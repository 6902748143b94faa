"""docsift.sources"""
