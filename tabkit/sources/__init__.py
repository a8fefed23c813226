"""Reading and writing tables, dictionaries, predictions and models."""
