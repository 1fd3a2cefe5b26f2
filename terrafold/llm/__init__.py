"""Operators for preparing training corpora. Nothing outside this folder imports it but the guarded entry point."""
