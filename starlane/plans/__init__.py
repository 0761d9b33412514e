"""starlane.plans"""
