"""Where records come from: message topics, files, and raw API items."""
