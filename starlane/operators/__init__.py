"""starlane.operators"""
