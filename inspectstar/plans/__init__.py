"""The builds: nine dimensions, two facts, and the jobs that write them."""
