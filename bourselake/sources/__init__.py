"""Reading and writing the lake, its layout and its file manifest."""
