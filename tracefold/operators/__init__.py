"""DataFrame operators: sessions, skew handling, model tables and replay."""
