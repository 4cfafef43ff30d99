"""Reading raw exports, listing files, and replacing stored days."""
