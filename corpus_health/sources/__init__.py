"""Reading surveys, listings and inventories; writing files and reports."""
