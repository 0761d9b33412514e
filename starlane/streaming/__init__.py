"""starlane.streaming"""
