"""Writers of lake zones."""
