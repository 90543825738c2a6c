"""Layered (bronze -> silver -> gold) analytics as plain DataFrame functions."""
