"""Whole stages, composed of operators: lazy DataFrame -> DataFrame functions."""
