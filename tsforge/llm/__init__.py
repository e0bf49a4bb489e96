"""Training-data operators over text, vector and page tables; nothing outside imports this package."""
