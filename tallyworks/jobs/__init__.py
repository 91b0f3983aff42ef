"""Command-line jobs over files of the user."""
