"""starlane.sources"""
