"""Writers. These are the only functions here that run a job of their own accord."""
