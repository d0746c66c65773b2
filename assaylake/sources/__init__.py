"""Reading and writing bronze, and extracts from raw files."""
