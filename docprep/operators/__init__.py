"""Operators of document preparation: column expressions, and DataFrame functions where rows are grouped or joined."""
