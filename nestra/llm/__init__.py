"""Operators of the problems tagged llm; nothing else in the library imports them."""
