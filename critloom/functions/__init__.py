"""Catalyst expressions: prompt rendering, score parsing, text helpers."""
