"""Reading and writing of text tables, predictions and run logs."""
