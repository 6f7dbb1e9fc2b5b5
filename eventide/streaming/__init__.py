"""Structured Streaming forms: replay harness, declarative append-mode
operators, and ``transformWithStateInPandas`` processors for per-key timers."""
