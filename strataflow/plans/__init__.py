"""What the layers contain: silver cleaning, gold models, and how they are run."""
