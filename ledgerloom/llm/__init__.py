"""Training-data operators over document, page and benchmark tables."""
