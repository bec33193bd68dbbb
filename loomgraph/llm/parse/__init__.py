"""Generalised LL recognition of source files, and the grammars of the supported languages."""
