"""Readers and writers: trips, requests, stage tables, metric tables, models."""
