"""Readers and writers for listings, images, request logs, runs and models."""
