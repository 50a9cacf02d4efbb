"""The composed jobs a user calls."""
