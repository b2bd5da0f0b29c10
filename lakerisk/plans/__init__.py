"""Domain views, batch runs, and the catalogue of checked queries."""
