"""A package, so that modules here may have the names of modules in the folder above."""
