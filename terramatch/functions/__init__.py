"""Column functions: geodesy, grid arithmetic, keys and names."""
