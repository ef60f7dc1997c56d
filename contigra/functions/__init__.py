"""Scalar expressions, all inside whole-stage code generation."""
