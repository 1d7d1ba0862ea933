"""Reading landed files, storing layers, generating source-shaped data."""
