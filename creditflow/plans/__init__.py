"""Stages composed of operators, the derived inputs, and the registered queries."""
