"""Column functions: text cleaning, message payloads, labels."""
