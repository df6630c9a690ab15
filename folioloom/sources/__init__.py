"""Where books come from and where catalogue records go."""
