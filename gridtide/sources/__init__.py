"""Reading and writing the layers."""
