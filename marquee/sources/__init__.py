"""Reading and writing titles and reviews."""
