"""Operators for preparing training text, each as DataFrame functions; nothing else in the library imports this."""
