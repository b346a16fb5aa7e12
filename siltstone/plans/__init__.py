"""Declared sources and products, end-to-end jobs and the registered queries."""
