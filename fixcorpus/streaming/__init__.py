"""The stateless gate and the stateful parts around it on streams."""
