"""Stages, sinks and progress metrics."""
