"""Files in, files and tables out."""
