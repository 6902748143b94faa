"""docsift.plans"""
