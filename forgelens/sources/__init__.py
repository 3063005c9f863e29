"""Where records come from and where relations are written."""
