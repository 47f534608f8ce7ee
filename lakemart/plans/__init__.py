"""Marts, the question catalogue and the registered queries."""
