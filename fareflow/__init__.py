"""Ride-stream analytics as DataFrame functions."""
