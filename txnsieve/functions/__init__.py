"""Column builders without state: text, payload and score helpers."""
