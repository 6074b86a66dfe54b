"""Column expressions; everything here stays inside Catalyst except the address codec."""
